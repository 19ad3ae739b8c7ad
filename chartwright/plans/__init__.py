"""End-to-end job plans and session settings."""
