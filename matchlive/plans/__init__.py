"""Analytics tables and the views built on them."""
