"""What each layer computes, as DataFrame to DataFrame functions."""
