"""Column expressions over points and timestamps."""
