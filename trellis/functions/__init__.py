"""trellis.functions"""
