"""End-to-end plans: the trusted loads, the book build and the mart views."""
