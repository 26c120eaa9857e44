"""Reading landed files and turning each source into canonical features."""
