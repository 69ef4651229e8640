"""Jobs: operators put together from files to results."""
