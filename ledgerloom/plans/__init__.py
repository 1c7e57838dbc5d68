"""The tables a user asks for, each a function from DataFrames to a DataFrame."""
