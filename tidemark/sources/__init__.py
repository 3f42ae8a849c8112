"""Where events come from and where files go."""
