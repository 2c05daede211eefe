"""Compositions of operators: preprocessing, training, benchmark, the job and the report views."""
