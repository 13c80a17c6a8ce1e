"""DataFrame operators: cleaning, profiling, linkage, scoring, detection, investigation."""
