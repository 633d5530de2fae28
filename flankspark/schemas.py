"""Types of the tables that are read from text; nothing is inferred."""

from __future__ import annotations

HSP = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double, qlen int, slen int, sstrand string"
DATABASES = "label string, path string"
SAMPLES = "sample string, fastq_1 string, fastq_2 string"
SRA = "Accession string, Submission string, Bases string, Sample string, Type string, BioSample string"
IDXSTATS = "reference string, length long, mapped long, unmapped long"
