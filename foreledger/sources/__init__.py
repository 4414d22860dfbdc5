"""Where rows come from: tables on disk, feed documents, the event-log adapter."""
