"""Composite operators (PL1-PL12): whole jobs as one DataFrame expression each."""
