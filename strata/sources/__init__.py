"""Sources, sinks and catalog: raw views, delimited-file ingest, table DDL and writes."""
