"""Table-level plans: cleaner specifications and the stage functions that run them."""
