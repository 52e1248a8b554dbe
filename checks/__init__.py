"""What the driver runs: every operator as a query on the test tables, with check SQL for a second engine."""
