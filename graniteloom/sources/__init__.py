"""graniteloom.sources"""
