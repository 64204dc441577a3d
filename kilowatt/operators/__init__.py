"""DataFrame-in / DataFrame-out operators, grouped by medallion layer."""
