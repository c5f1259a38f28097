"""Raw inputs."""
