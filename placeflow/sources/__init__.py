"""Sources and sinks: fragments, the geocode cache, exchange CSV, delimited replies, pages."""
