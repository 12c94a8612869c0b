"""Reading and writing series, runs and fitted artefacts."""
