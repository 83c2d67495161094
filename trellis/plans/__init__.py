"""trellis.plans"""
