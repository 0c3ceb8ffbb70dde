"""Tables in and out, and the checks that run on them."""
