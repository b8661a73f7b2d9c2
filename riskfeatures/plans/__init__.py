"""Feature plans: one lazy DataFrame plan per feature block."""
