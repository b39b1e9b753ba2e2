"""armlens.plans"""
