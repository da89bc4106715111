"""retailstar.operators"""
