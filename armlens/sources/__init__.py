"""armlens.sources"""
