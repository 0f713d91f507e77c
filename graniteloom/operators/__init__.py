"""graniteloom.operators"""
