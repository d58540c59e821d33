"""Writers: messages, listings, archives, dead letters, states, positions."""
