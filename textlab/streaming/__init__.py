"""Jobs on live feeds."""
