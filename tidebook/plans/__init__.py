"""What a run is about: the scenario, the reporting lines, the staged run."""
