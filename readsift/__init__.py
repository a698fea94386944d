"""Find viral sequences in large sets of sequencing reads, as Spark DataFrame jobs."""
