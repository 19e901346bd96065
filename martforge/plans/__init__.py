"""Plans: the layered build, query registry, sinks and the pipeline."""
