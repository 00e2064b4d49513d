"""Reading and writing: files, tables, event streams, generated inputs."""
