"""Training-data operators. Nothing else in feedloom imports this subpackage."""
