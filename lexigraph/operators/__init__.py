"""Table-in, table-out jobs: analysis, index, search, fusion, links, evaluation."""
