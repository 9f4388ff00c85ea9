"""Models, reports, digests, checks and the jobs that run them."""
