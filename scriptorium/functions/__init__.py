"""Column functions: text, file names and model replies."""
