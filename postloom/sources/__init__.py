"""Where frames come from: tables, topics, and the posts of the test tables."""
