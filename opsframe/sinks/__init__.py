"""Writers: metric files, lines, mates, ids and reports."""
