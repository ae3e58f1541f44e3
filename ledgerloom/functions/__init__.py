"""Column expression builders shared by every operator."""
