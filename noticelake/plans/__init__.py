"""Multi-step jobs composed from sources, functions and operators."""
