"""Plans that combine sources and operators into whole runs."""
