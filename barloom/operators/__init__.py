"""The indicator families."""
