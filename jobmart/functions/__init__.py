"""Column → Column normalisers.  None runs an action, so batch and streams share them."""
