"""Training-data operators: quality, media, near duplicates, mixing, licences, packing, repeats, toxicity, urls, fingerprints, divergence of sources, periodic runs, BPE."""
