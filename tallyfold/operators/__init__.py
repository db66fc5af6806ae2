"""DataFrame operators over update feeds and metric state."""
