"""Text analytics over posts and articles, as DataFrame-to-DataFrame functions."""
