"""Tables, landed payloads and their normalisers."""
