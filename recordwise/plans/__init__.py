"""The fixed reports: presets of the general operators over the feature table."""
