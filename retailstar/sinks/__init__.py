"""retailstar.sinks"""
