"""Document dataflow engine: documents as ordered tables of pages, lines, cells and boxes."""
