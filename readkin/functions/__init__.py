"""Column expressions over sequences, qualities and alignments."""
