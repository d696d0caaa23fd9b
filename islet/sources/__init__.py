"""islet.sources"""
