"""Month snapshots, their readers, the drop list, and writers for results."""
