"""retailstar.plans"""
