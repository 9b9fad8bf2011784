"""crease.operators"""
