"""Column functions: text normalisation, similarity, geo maths, signal columns."""
