"""Entity resolution, fixed-grain marts, data-quality and measurement jobs."""
