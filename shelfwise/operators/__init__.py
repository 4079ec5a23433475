"""DataFrame to DataFrame operators, one module per step of the document and answer path."""
