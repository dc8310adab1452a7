"""Sources: message logs, files, row collections and generated rows."""
