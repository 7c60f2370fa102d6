"""Sources: station line files, listing pages, Kafka rows, and adapters that
derive the library's input shapes from the provided test tables."""
