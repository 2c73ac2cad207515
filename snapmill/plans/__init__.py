"""Jobs that move whole month ranges from layer to layer."""
