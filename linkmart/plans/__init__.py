"""Entity specs, the model graph built from them, and the refresh job."""
