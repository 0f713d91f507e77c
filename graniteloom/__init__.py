"""graniteloom: a DataFrame-native analytics engine for source-code corpora."""
