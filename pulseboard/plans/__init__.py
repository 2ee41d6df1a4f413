"""Named datasets: silver, gold, the older unified view and the reports."""
