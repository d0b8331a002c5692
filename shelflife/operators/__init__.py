"""DataFrame operators: activity, inventory, discovery, readiness and reports."""
