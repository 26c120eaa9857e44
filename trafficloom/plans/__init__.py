"""Jobs: build every source, merge, cut tiles, write the catalogue."""
