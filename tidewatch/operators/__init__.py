"""DataFrame-to-DataFrame operators: matching, comments, merging, changes, top-k."""
