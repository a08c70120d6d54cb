"""Plans that spread one long series over many tasks: bounded frames and recurrences."""
