"""The jobs a user calls: ledger, field sales, dimensions, targets, inventory, marts."""
