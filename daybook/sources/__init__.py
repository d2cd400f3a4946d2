"""Sources and sinks: table I/O, record normalisers, archives, snapshots."""
