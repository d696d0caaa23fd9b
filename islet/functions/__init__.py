"""islet.functions"""
