"""Staging models, marts, panels, and the whole build."""
