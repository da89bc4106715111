"""retailstar.sources"""
