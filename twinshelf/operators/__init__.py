"""DataFrame operators: selection, vectors, candidates, similarity, linkage, clustering."""
