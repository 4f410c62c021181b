"""Sources and sinks: files, pages, elements, catalog tables."""
