"""What the operators are put together to: cleaning, consolidation, analytics, the whole job."""
