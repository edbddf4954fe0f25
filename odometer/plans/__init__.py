"""Named query plans (the contract) and their SQL oracles."""
