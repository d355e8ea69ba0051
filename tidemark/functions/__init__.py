"""tidemark package."""
