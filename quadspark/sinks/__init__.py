"""Writers: quads to line files, graph blocks and partitioned tables."""
