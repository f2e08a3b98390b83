"""Explicit schemas of what the engine reads and writes; nothing is inferred."""

GENOMES = "genome_id string, record_idx int, record_id string, description string, category string, seq string, path string"
CATALOG_ITEM = "struct<accession: string, create_date: string, title: string>"
HITS_12 = "qseqid string, sseqid string, pident double, length int, mismatch int, gapopen int, qstart int, qend int, sstart int, send int, evalue double, bitscore double"
HITS_4 = "qseqid string, sseqid string, pident double, length int"
PREDICTIONS = "name string, prediction string, score double"
#: A catalog's keys, and the categories that they hold, in their order.
CATALOG_KEYS = {"bacterial": "bacteria", "viral": "virus", "archaea": "archaea", "plasmid": "plasmid"}
