"""Every operator as a query on the driver's tables, and its independent SQL."""
