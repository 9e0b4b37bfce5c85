"""Column functions for events, payloads and signatures."""
