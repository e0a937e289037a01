"""Models and reports, each a function from frames to a frame."""
