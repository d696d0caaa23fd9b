"""islet.operators"""
