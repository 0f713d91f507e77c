"""graniteloom.functions"""
