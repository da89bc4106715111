"""retailstar.functions"""
