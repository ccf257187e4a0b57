"""Where finished reports go."""
