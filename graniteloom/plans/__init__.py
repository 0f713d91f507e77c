"""graniteloom.plans"""
