"""Tables, landing files and payload documents."""
