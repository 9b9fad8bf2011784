"""crease.sources"""
