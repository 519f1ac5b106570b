"""Barcode tallies and jackpot statistics for sequencing reads on Spark."""
