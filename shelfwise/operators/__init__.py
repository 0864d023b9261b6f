"""DataFrame -> DataFrame operators: cleaning, features, profiling,
modeling, metrics and recommendations."""
