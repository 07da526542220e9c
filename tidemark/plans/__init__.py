"""Plan-level building blocks: join policy, publish and loads, history, refresh."""
