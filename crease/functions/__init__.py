"""crease.functions"""
