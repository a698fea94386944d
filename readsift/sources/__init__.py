"""Readers and writers: FASTQ, FASTA, hit tables, taxonomy, reports."""
