"""graniteloom.streaming"""
