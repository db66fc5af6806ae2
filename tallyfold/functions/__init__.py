"""Column functions: number text, JSON codec, signing, status codes."""
