"""The table layers and what is served from them."""
