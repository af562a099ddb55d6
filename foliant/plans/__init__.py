"""End-to-end jobs (listener, matcher, planner, processor) and fixture wiring."""
