"""JSON messages: publish, subscribe, parse, store."""
