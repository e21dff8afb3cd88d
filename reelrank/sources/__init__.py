"""Sources and sinks: text loaders, stream messages, domain views, table I/O."""
