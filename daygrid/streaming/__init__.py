"""The load as a stream: new landed files are picked up as they arrive."""
