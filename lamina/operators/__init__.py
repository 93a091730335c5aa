"""DataFrame operators of the batch layers: ingest (stack + lineage), clean
(names, dedup, filters, trim, audit), enrich (dimension joins, defaults,
decoding), indicators (leaf statistics, roll-up, lags, deltas), profile
(counts, nulls, distributions, duplicate keys) and features (model frame)."""
