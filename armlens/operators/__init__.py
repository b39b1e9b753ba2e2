"""armlens.operators"""
