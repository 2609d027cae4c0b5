"""DataFrame operators of the barcode-family pipeline."""
